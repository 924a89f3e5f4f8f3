"""Academic records on Spark: feeds, rules, keys, commands, reports."""
