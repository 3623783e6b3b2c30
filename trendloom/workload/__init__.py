"""The library's operators and plans, run over a retail schema's tables."""
