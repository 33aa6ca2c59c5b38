from .tables import read_table, fixture, fixture_cte, TABLES  # noqa: F401
