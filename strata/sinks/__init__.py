"""Writers: table replace, partitioned writes, upsert, fresh-directory publishing and upkeep."""
