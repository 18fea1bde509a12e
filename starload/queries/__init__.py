"""The registered queries: every operator run over price bars derived from the test tables."""
