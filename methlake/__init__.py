"""methlake: single-cell methylation analytics as DataFrame-to-DataFrame operators on Spark."""
