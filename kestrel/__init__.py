"""kestrel: analytics-engineering operators on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a
``Column`` builder) written with Spark's own SQL, window and partition
features.  Sub-packages:

* ``sources``   - driver tables, stand-in views, seeds, landed JSON
* ``functions`` - column-level rules (mapping, growth, units, levels, e-mail)
* ``operators`` - analytical patterns, bars, marts, data-quality checks
* ``plans``     - storage-touching jobs: partition publish, merge, WAP
* ``streaming`` - incremental (file-arrival) driver for the daily bar job
"""

from kestrel.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
