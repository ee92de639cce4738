"""Tidelane: DataFrame-to-DataFrame operators for episodic multi-stream recordings."""
