"""File-source streams: the raw layer and its history kept up to date."""
