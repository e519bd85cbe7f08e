"""DataFrame-to-DataFrame operators: ranking, monthly series, scoring."""
