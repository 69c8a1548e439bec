"""Sources: line text, bounded side files, structured model responses."""
