"""Composite jobs: feed imports (G1-G3), query suites (G4, G5) and the query catalogue."""
