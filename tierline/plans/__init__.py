"""Dataset specs, marts, layer jobs and the registered queries."""
