"""Training and scoring plans, and the registered queries."""
