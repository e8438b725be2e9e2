"""Column expressions shared by the plans (guarded ratios, clamps, labels, hashes)."""
