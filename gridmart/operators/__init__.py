"""Loading, merging, snapshots, audit and data-quality operators."""
