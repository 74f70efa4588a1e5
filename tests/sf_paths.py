"""Where the small test tables are (a module of its own: several folders have a conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
