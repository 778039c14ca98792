"""Writers: data tables, packages, stores, removal lists."""
