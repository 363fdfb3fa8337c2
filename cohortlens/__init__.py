"""cohortlens: survey cohort analytics on Spark DataFrames.

Clean and ordinal-encode answer columns, expand multi-value cells, z-score, sweep and fit
K-Means, name clusters by rank, then summarise cohorts: means, exact quantiles, category
mixes, top-N lists, two-way gradients, Pearson correlations and OLS with standard errors.
"""

__version__ = "0.1.0"
