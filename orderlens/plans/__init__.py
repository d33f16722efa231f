"""Jobs: training, scoring and reports composed of the operators."""
