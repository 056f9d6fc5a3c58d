"""Where rows and file names come from."""
