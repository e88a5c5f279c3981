"""Writers: keyed tables, snapshots, text, messages, dump exports."""
