"""Where the driver's small tables lie."""

SF_SMALL = "/root/testdata/sf0.001"
