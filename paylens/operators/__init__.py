"""Analytics operators: pure functions DataFrame(s) -> DataFrame."""
