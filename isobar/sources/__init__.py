"""Reading landed files, configuration, tables and logs; writing tables and exports."""
