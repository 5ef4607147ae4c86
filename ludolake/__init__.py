"""Game-store analytics as plain DataFrame-in / DataFrame-out functions on Spark."""
