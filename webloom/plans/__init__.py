"""The crawl store and what a user calls: batches, passes, loops and reports."""
