"""One query for each operator, over the test tables."""
