from betaloom.plans.pipeline import main

main()
