"""DataFrame-in, DataFrame-out operators.

Modules: ``quality`` (profiling, order checks), ``sampling`` (samples,
dense ids, seeded splits), ``aggregates`` (per-user / per-item statistics),
``similarity`` (co-ratings, cosine, neighbours), ``predict`` (baseline and
kNN predictions), ``recommend`` (popularity, kNN lists), ``als`` (matrix
factorisation), ``evaluate`` (errors over seeds), ``ordering`` (global
order without one-task windows).
"""
