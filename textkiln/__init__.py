"""textkiln: corpus building and analysis as Spark plans."""
