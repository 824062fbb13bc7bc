"""Layer plans, the star model, its measures and reports."""
