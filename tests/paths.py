"""Folders of the test tables (a module of its own name: there is more than one conftest)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"
