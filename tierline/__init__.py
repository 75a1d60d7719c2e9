"""tierline: layered (raw -> bronze -> silver -> gold) batch analytics on Spark.

Every operator is a function from DataFrame(s) to a lazy DataFrame, built only
from the DataFrame API so Catalyst can prune, push down and plan it.

Sub-packages:

* ``sources``   - CSV scans with declared schemas, table read/write/export.
* ``functions`` - column expressions (string cleaning, safe ratios, scores).
* ``operators`` - DataFrame operators (conform chain, de-duplication, global
  rank, top-k, marts' building blocks, data-quality audit).
* ``plans``     - dataset specs, marts, layer jobs and the registered queries.
"""

from tierline.session import scratch_path, shared_dir

__all__ = ["scratch_path", "shared_dir"]
