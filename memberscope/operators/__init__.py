"""The data products, each a function from DataFrames to a DataFrame.

- ``distributions`` – member distributions, sentinel split, heat, overview (A1–A5)
- ``funnel``        – conversion funnel (A6)
- ``growth``        – per-day rollup, growth line, daily counts, week on week (A7–A10)
- ``hotwords``      – hot words (A11)
- ``tags``          – the member tag table and its features (A12–A19)
- ``audience``      – selection, tag facets, coupon buckets (A20–A23)
- ``calendar_jobs`` – date normalisation, calendar fields, shifts, day differences (D1–D4)
- ``joins``         – dimension lookup join with optional salting
"""
