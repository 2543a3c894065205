"""Silver tables, gold metrics and marts as logical plans over the feeds."""
