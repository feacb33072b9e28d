"""campaignlake: advertising-campaign analytics on a layered lake, on Spark.

Sub-packages:
  sources    -- delimited files, JSON messages, JDBC, driver-table projection
  functions  -- column expressions and header helpers
  operators  -- cleaning, marts, features, model, BI, table lifecycle
  streaming  -- change feeds, message streams, stateful de-duplication
  plans      -- composite flows and the registered queries
"""

__version__ = "0.1.0"
