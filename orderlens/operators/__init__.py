"""Table operators: orders, returns, recommendations, quality, sampling, metrics, attributions."""
