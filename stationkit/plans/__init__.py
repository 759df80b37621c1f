"""Plan shapes shared by the operators: stored tables, key joins, global order."""
