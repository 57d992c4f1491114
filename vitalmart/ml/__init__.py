"""Training, scoring, evaluation and gating with MLlib."""
