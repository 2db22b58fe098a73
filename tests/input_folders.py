"""Input folders of the tests, in a module of its own: two ``conftest`` modules share one name."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
