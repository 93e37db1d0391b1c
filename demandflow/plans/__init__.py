"""Composite jobs: medallion tiers, forecast fact, growth marts, models and backtests."""
