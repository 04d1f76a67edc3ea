"""The catalogue of KPIs and the plans that run them."""
