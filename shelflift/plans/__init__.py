"""How operators are composed into layers and rebuilt in order."""
