"""vaultmart.plans"""
