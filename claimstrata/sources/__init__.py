"""Where rows come from: raw tables, files, and the stored layers."""
