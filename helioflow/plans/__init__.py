"""Views of the test tables, and the queries over them."""
