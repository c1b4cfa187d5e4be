"""Where rows come from: landed trip files, the zone lookup file."""
