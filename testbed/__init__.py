"""The library's queries on the given test tables, each next to the SQL it must agree with."""
