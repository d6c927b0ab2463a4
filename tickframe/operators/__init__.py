"""DataFrame operators (cleaning, windows, risk, screening, matrices, models)."""
