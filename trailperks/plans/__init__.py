"""Composed runs: the batch pipeline and the parameter scenarios."""
