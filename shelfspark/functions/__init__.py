"""Column functions; every one builds a native expression unless it says otherwise."""
