"""Monthly value reporting per production site, as Spark DataFrame stages."""
