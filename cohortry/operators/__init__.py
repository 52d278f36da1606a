"""Part of cohortry; see README.md."""
