"""The row-wise plans over a stream of landed snapshots."""
