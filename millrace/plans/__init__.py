"""Plan shapes shared by the operators: ordered scans of hot keys, panes, folds."""
