"""Reading connector configs, snapshots, catalogs and landed logs."""
