"""The transaction log: actions, stores, snapshots, checkpoints and commits."""
