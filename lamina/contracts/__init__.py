"""Data contracts: model, types, checks, gate, generation, compilation, evolution."""
