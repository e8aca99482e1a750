"""Job-level plans: session settings and the extract → transform → load run."""
