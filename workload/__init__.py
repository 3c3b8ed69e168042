"""The library's operators bound to the test tables, with the equivalent SQL."""
