"""The test tables dressed as feeds, with SQL that states the expected results."""
