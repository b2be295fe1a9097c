"""Job-level plans: landing, cleaning, final load, dashboard, whole pipeline."""
