"""stresscast."""
