"""Named queries over the star and text tables, with the SQL each must equal."""
