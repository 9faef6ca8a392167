"""Column-level building blocks: naming, headers, labels, routing, histograms."""
