"""Cold-chain analytics on Spark: telemetry quality, spoilage risk and rerouting."""
