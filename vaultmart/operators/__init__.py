"""vaultmart.operators"""
