"""basketflow — retail-basket feature engineering on Spark DataFrames.

Six typed sources -> shared facts (order timeline, order lines, user x product
pairs) -> 54 feature operators -> three feature tables -> data-quality checks
-> ML dataset.  All work is declared with the DataFrame API; Catalyst and AQE
pick the physical plan.
"""

from basketflow.sources.readers import Sources

__all__ = ["Sources"]
