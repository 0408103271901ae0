"""Table-to-table operators; each returns a lazy DataFrame unless it says otherwise."""
