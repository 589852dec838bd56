"""Named queries of the engine and their reference SQL."""
