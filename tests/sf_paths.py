"""Where the given tables lie."""

SF_SMALL = "/root/testdata/sf0.001"
