"""podium: competition-results analytics as Spark DataFrame operators.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or
``Column``) objects; nothing is collected to the driver and no Python UDF is
used.  Sub-packages:

* ``functions``  - column expressions (text cleaning, tolerant numbers, free-text
  dates, half-even rounding, threshold bands, display formatting)
* ``operators``  - generic relational building blocks (best/first/top-N per
  group, scalable global places, window membership, pivots, unions)
* ``sources``    - HTML table extraction, link extraction, CSV supplement, table
  sinks/sources, JSON record sink
* ``plans``      - the leaderboards and reports composed from the above, plus the
  binding of the engine schema to the supplied TPC-H-style tables
* ``streaming``  - incremental recompute of the boards as new results arrive

``llm`` is a folder of its own with training-data operators, which nothing here
imports; its modules say where they use Arrow batches.
"""

__version__ = "0.1.0"
