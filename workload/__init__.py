"""Star-schema test views, registered queries and their SQL counterparts."""
