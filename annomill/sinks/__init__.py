"""Writers.  Every one overwrites its target."""
