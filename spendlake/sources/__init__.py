"""Where rows come from: tables, exports, id lists, inventories, registries, footers."""
