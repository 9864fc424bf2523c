"""DataFrame -> DataFrame steps; none of them asks whether its input is static or streaming unless it says so."""
