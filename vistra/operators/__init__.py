"""DataFrame → DataFrame operators of the visit pipeline and the search."""
