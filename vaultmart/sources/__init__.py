"""vaultmart.sources"""
