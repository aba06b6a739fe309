"""Feature operators (stand-alone queries), sequence operators and
data-quality checks."""
