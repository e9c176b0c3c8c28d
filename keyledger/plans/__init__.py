"""Job plans (J1-J9) and the registered queries with their SQL oracles."""
