"""Writers of output tables and of the manifest that lists them."""
