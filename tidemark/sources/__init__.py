"""Where rows come from and go to: stored tables, CSV minutes, pandas."""
