"""tallygrove: registry-style snapshot analytics expressed as Spark plans."""
