"""Relational operators over event catalogs, cell-day series and scores."""
