"""Where rows go: month folders, warehouse tables, snapshots, a database."""
