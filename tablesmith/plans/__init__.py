"""Table definitions and the plans that build, summarize and report on them."""
