"""Business plans: airport names, the day x airport spine, the seven daily
metrics and the fused daily mart."""
