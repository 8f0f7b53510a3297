"""Supply-chain risk mart on Spark: raw records to star schema to risk views."""
