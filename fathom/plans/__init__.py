"""Base tables that queries share: bars, daily series and cross-section panels."""
