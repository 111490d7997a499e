"""Named queries over the driver tables, each next to the SQL that must give the same rows."""
