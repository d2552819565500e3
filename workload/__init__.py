"""The library's queries over the benchmark tables, with reference SQL."""
