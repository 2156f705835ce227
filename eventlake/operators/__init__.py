"""DataFrame-to-DataFrame steps; all but those that say so also work on streams."""
