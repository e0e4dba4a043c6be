"""DataFrame operators over events and marts."""
