"""Reading catalogs of datasets and listings of files; writing datasets."""
