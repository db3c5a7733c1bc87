"""Reading of the exports, and snapshots of both layers."""
