"""What the tests of the operators share besides fixtures."""

SF_DIR = "/root/testdata/sf0.001"
