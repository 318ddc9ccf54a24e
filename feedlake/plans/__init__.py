"""The three table builds, the reports and the maintenance queries."""
