"""Plan patterns that keep skewed keys and global orders distributed."""
