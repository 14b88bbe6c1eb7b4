"""Structured Streaming variants: stateless scoring of arriving members and
windowed monitoring (event rates, score drift) with watermarks."""
