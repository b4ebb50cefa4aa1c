"""Reading and writing: tables, manifests, uploaded files, write-once stores, reports."""
