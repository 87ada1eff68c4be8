"""Views over the findings table: newest copies, typed and scored rows, lookups and comparisons."""
