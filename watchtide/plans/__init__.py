"""Reports and hunting queries over the views."""
