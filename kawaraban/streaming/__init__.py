"""The batch jobs, run for each batch of pages that lands in a folder."""
