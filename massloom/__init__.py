"""massloom: LC-MS/MS feature, identification and quality-control operators as Spark jobs."""
