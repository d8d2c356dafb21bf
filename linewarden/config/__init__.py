"""Default rule, limit and risk configuration."""
