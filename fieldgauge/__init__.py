"""fieldgauge: sensor-telemetry analytics written as Spark DataFrame operators."""
