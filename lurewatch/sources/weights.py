"""Linear scorer held as data: tabular weights, term weights, thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lurewatch.schema import FEATURES, PHISH_THRESHOLD, SUSPECT_THRESHOLD

# --- Fixed values: the deployed linear scorer, feature -> (coef, mean, scale). ---
TAB_WEIGHTS = {
    "url_count": (-0.6655753406728825, 0.9309090909090909, 0.4780792608075924),
    "url_has_ip": (0.06785673714408436, 0.05606060606060606, 0.2300387239329982),
    "url_max_len": (-0.9221108403667512, 29.186060606060607, 13.930626373133617),
    "url_max_subdomains": (0.4006815355723652, 1.010909090909091, 0.6521775350240717),
    "url_has_at_symbol": (0.0, 0.0, 1.0),
    "url_uses_shortener": (0.35373982092546474, 0.046363636363636364, 0.21027137129618684),
    "url_suspicious_tld": (0.29799625481328473, 0.2675757575757576, 0.44269512255447035),
    "url_https_ratio": (-0.12789753470490506, 0.7681818181818182, 0.421993498050251),
    "url_max_entropy": (0.5469909291416047, 2.053607472877154, 1.0498482375155773),
    "lookalike_brand_distance": (-0.3043566569920168, 4.764242424242425, 2.467521183235376),
    "digit_letter_substitution": (0.09386361349260235, 0.1290909090909091, 0.33530053128646947),
    "has_homoglyph": (0.020117440538923868, 0.041212121212121214, 0.19878048766748158),
    "sender_display_domain_mismatch": (0.05585337914955447, 0.21, 0.40730823708832653),
    "reply_to_mismatch": (-0.12336173706228827, 0.19151515151515153, 0.3934934538912806),
    "free_provider_official_claim": (0.05033042651780025, 0.1321212121212121, 0.3386224998856839),
    "sender_suspicious_tld": (0.17928033681317246, 0.22303030303030302, 0.4162784968750084),
    "urgency_term_count": (1.0152720551382735, 1.6833333333333333, 2.1035383850487896),
    "credential_term_count": (-0.1645518730085798, 0.9148484848484848, 1.1735819843593518),
    "lure_term_count": (0.3086439569017057, 0.25363636363636366, 0.9876059764593557),
    "generic_greeting": (0.04272072348598183, 0.25272727272727274, 0.4345758833013062),
    "exclamation_ratio": (-0.21308110353817325, 0.0008877445645199865, 0.0038263534019916663),
    "uppercase_ratio": (0.1721130028331869, 0.050327442959282556, 0.021813351534817605),
    "spf_fail": (-0.07034165072748545, 0.25606060606060604, 0.43645569315164406),
    "dkim_fail": (-0.002623590013316217, 0.1603030303030303, 0.3668868610058173),
    "dmarc_fail": (-0.045096346626113115, 0.20575757575757575, 0.40425412276925926),
    "auth_missing": (0.013870824712044226, 0.05909090909090909, 0.23579476998805168),
    "has_attachment": (-0.15992877451170506, 0.16090909090909092, 0.36744707832815743),
    "dangerous_attachment": (0.016140209180984865, 0.09909090909090909, 0.2987840371011196),
    "body_length": (1.3841509982177238, 288.35818181818183, 61.361197464439655),
    "link_text_mismatch": (0.0, 0.0, 1.0),
}
INTERCEPT = -0.3217947084627873

#: Its 400 exported terms of one or two words, term -> (weight, idf).
TERM_WEIGHTS = {
    "82": (-1.3978608042517582, 6.329392009613412),
    "33 82": (-1.2094501706740985, 7.492542819419093),
    "41": (-0.8468195589254955, 6.393930530750983),
    "compte amazon": (-0.7936491568900691, 4.974846346808102),
    "amazon ete": (-0.734307144019998, 6.704085459054823),
    "monsieur vous": (-0.7213031121669727, 4.758175309999509),
    "parametres google": (0.6904241849364666, 5.605473170386713),
    "google consultez": (0.6904241849364666, 5.605473170386713),
    "bonjour profitez": (-0.6843544272477944, 5.230779720945302),
    "bonjour une": (-0.6757290599150004, 5.150737013271765),
    "alerte": (-0.6717848731693241, 3.2818978015008313),
    "41 ou": (-0.6646335508796691, 7.15607058279788),
    "wonka": (-0.6616734855514054, 5.3643111135698245),
    "cadeau google": (-0.6519461816949524, 6.537031374391656),
    "google de": (-0.6514557349868051, 6.393930530750983),
    "50": (0.6290895639998925, 4.111548145074456),
    "1000 reclamez": (0.6255368904346345, 4.9275934619575565),
    "de 1000": (0.6255368904346345, 4.9275934619575565),
    "1000": (0.6255368904346345, 4.9275934619575565),
    "humaines wonka": (-0.6180758366736642, 6.211608973957028),
    "votre espace": (-0.6147621528791638, 3.1205665205987128),
    "linkedin hello": (0.6078468015351918, 6.4629234022379345),
    "client votre": (-0.6062771215227972, 4.69526148458894),
    "operation": (-0.604387419963504, 4.091345437756937),
    "11h00 lieu": (0.6027115963355074, 6.537031374391656),
    "11h00": (0.6027115963355074, 6.537031374391656),
    "2026 11h00": (0.6027115963355074, 6.537031374391656),
    "13": (-0.5816392409225899, 6.05745829412977),
    "nouvelle operation": (-0.5676891130145312, 4.958846005461661),
    "operation sur": (-0.5676891130145312, 4.958846005461661),
    "alerte nouvelle": (-0.5676891130145312, 4.958846005461661),
    "vos coordonnees": (0.5650232881277261, 3.7838607380089764),
    "une adresse": (0.5598821819549408, 3.8086759071287006),
    "adresse incomplete": (0.5598821819549408, 3.8086759071287006),
    "14h bonjour": (0.5457018629764449, 6.393930530750983),
    "regles": (-0.542654666717764, 4.265698824901715),
    "regles pour": (-0.542654666717764, 4.265698824901715),
    "etre regles": (-0.542654666717764, 4.265698824901715),
    "microsoft support": (-0.5419725583690541, 4.591121225336343),
    "ici url_token": (0.5411380480313565, 2.84239926778827),
    "mreci de": (-0.5377829421535424, 7.7156863707333025),
    "mreci": (-0.5377829421535424, 7.7156863707333025),
    "coordonnees": (0.5334236582172478, 3.028936197752788),
    "sncf": (0.531614299631196, 6.4629234022379345),
    "thomas": (0.5311916112935205, 5.464394572126807),
    "11": (-0.5286934135583626, 5.636244829053466),
    "coordonnees bancaires": (0.528485852900736, 3.031243003850703),
    "sous": (0.5265717583874485, 2.2529144492197357),
    "sera": (0.5265717583874485, 2.2529144492197357),
    "paie merci": (0.524610617320375, 3.7887747528114057),
    "demande": (-0.5222020887336359, 3.6682587282989534),
    "url_token amazon": (0.5178074797785621, 5.575620207237032),
    "39": (-0.5124025582850457, 5.388408665148885),
    "fedex": (0.5111745003463013, 4.707531577180754),
    "microsoft verification": (0.5045853559336796, 6.537031374391656),
    "avez nouvelles": (0.5041636684690917, 5.388408665148885),
    "nouvelles notifications": (0.5041636684690917, 5.388408665148885),
    "notifications": (0.5041636684690917, 5.388408665148885),
    "confirmee cher": (0.50389219925526, 6.799395638859147),
    "30": (-0.5033612672541219, 6.393930530750983),
    "us vons": (-0.5008758285836699, 6.4629234022379345),
    "vons": (-0.5008758285836699, 6.4629234022379345),
    "vons temporairement": (-0.5008758285836699, 6.4629234022379345),
    "google support": (0.49600823284992107, 4.9275934619575565),
    "cette": (-0.4899336111195229, 3.474359618162556),
    "32": (-0.4899326663832919, 6.704085459054823),
    "15": (-0.48896490851115076, 4.853485489803834),
    "client nous": (0.4879324535914454, 3.4707689500318275),
    "inhabituelle bonjour": (0.4835787193417169, 5.883104906984992),
    "garcia consulte": (0.4834908521985894, 7.7156863707333025),
    "notifications hello": (0.4805830305550836, 6.6170740820651925),
    "ici": (0.4775955840124255, 2.352049538064623),
    "ameli verifiez": (0.47661960423203303, 6.268767387796977),
    "24h voter": (-0.47599741184140276, 7.7156863707333025),
    "docusign": (-0.47420794081237294, 5.041537721306773),
    "92": (-0.4737110931157673, 6.268767387796977),
    "ordinateur google": (0.4735604494315591, 4.9275934619575565),
    "compte google": (0.47314999658948126, 4.825314612837138),
    "40 cher": (-0.4718235789483762, 7.7156863707333025),
    "microsoft cher": (0.46805882778165403, 6.6170740820651925),
    "89": (0.46568560520898217, 5.170155099128867),
    "garcia": (0.4630489838298617, 6.537031374391656),
    "amazon hello": (0.45123387123401076, 7.7156863707333025),
    "client us": (-0.4504344109989907, 6.268767387796977),
    "dans votre": (-0.45014800655358184, 3.5035587728548183),
    "expediteur amazon": (0.448242159337608, 5.518461793397083),
    "amazon livraison": (0.448242159337608, 5.518461793397083),
    "aucune": (-0.4476773997521935, 3.378395629900812),
    "paie": (0.4461247526956645, 3.778970752714785),
    "madame monsieur": (-0.4418985215530551, 3.038195523165585),
    "madame": (-0.4418985215530551, 3.038195523165585),
    "monsieur": (-0.4418985215530551, 3.038195523165585),
    "voter compte": (-0.4406117075723101, 6.537031374391656),
    "orange hello": (0.4406001149434067, 7.492542819419093),
    "laura moreau": (-0.4368828553883173, 7.7156863707333025),
    "compte sera": (0.43685682552451227, 2.7117400647878434),
    "les tendances": (0.4365225596727537, 5.605473170386713),
    "tendances": (0.4365225596727537, 5.605473170386713),
    "tendances du": (0.4365225596727537, 5.605473170386713),
    "us": (-0.43623976538800285, 5.734684901866719),
    "espace": (-0.4361344723637803, 3.1130193149633296),
    "aucune action": (-0.43548757118944326, 3.3816689552457815),
    "livraison madame": (-0.4343546814839318, 6.010938278494877),
    "client laposte": (-0.43026446734002294, 5.605473170386713),
    "spotify activite": (-0.4214165398268448, 7.022539190173357),
    "nouvelles": (0.420109784782343, 4.211631603631439),
    "99 votre": (-0.4188029548441448, 4.784492618316882),
    "10": (0.41879459272445985, 6.211608973957028),
    "compte orange": (0.4187057117582096, 5.076629041118044),
    "requise hello": (-0.41807175280615255, 6.4629234022379345),
    "laura": (-0.4170441268763057, 4.943097648493521),
    "de paie": (0.41409302405851234, 3.778970752714785),
    "12": (0.4117530452890619, 4.281699166248156),
    "tout david": (0.410996894420624, 7.022539190173357),
    "selection bonjour": (0.40866052499513367, 7.310221262625138),
    "votre activite": (-0.4080095817967888, 5.464394572126807),
    "recapitulatif de": (-0.4080095817967888, 5.464394572126807),
    "recapitulatif": (-0.4080095817967888, 5.464394572126807),
    "64": (0.4071596961888962, 6.537031374391656),
    "espace client": (-0.405896037048429, 3.1256298225552595),
    "29": (0.40373457662748363, 5.464394572126807),
    "etes": (-0.40179349750896587, 3.1461433623883623),
    "vous etes": (-0.40179349750896587, 3.1461433623883623),
    "tout thomas": (0.40078411446581547, 7.310221262625138),
    "reglse": (0.39978486312731487, 7.7156863707333025),
    "reglse pour": (0.39978486312731487, 7.7156863707333025),
    "etre reglse": (0.39978486312731487, 7.7156863707333025),
    "google": (0.3996094747769569, 3.7220833783127336),
    "url_token netflix": (-0.3989058169878696, 5.769776221677989),
    "facture": (0.3981252648642996, 3.70381803033544),
    "votre achat": (-0.3956164669994382, 5.251833130143134),
    "pour votre": (-0.3956164669994382, 5.251833130143134),
    "merci pour": (-0.3956164669994382, 5.251833130143134),
    "achat": (-0.3956164669994382, 5.251833130143134),
    "achat bonjour": (-0.3956164669994382, 5.251833130143134),
    "fedex votre": (0.3953678438461359, 6.211608973957028),
    "david petit": (-0.3914143825521994, 7.7156863707333025),
    "87": (0.3909499849153611, 6.4629234022379345),
    "apple cher": (0.3906872239473255, 5.843884193831711),
    "adresse": (0.38971006545129977, 2.8893746361016746),
    "71 ou": (-0.38816063306782483, 7.7156863707333025),
    "25 07": (0.3880230784879535, 7.492542819419093),
    "notifications cher": (0.3872198396583877, 7.310221262625138),
    "client vous": (-0.386466722951982, 4.784492618316882),
    "40 ou": (-0.3861753497666082, 7.7156863707333025),
    "votre recu": (0.3849356795773073, 5.388408665148885),
    "sophie nous": (0.38403530296979355, 7.15607058279788),
    "bonjour sophie": (0.38403530296979355, 7.15607058279788),
    "hello une": (0.3827134753567823, 5.388408665148885),
    "lyon": (0.38130928059907915, 5.4910628192089685),
    "depuis lyon": (0.38130928059907915, 5.4910628192089685),
    "lyon le": (0.38130928059907915, 5.4910628192089685),
    "disponible cher": (0.38075091394514154, 7.15607058279788),
    "decouvrez": (-0.3803027213686025, 5.170155099128867),
    "une": (0.3793654120313505, 1.7393354614353687),
    "500 reclamez": (-0.37934731908147995, 4.943097648493521),
    "55 ou": (-0.37775359060629876, 7.7156863707333025),
    "129": (-0.3772526839840866, 5.189957726425047),
    "04 2026": (-0.37608460704159047, 5.636244829053466),
    "04": (-0.37608460704159047, 5.636244829053466),
    "date 22": (0.3756415369571445, 7.15607058279788),
    "le 08": (0.3742322630631884, 7.15607058279788),
    "tout maxime": (0.3739310774433237, 7.15607058279788),
    "de 129": (-0.37150674222969826, 5.210160433742566),
    "00 sur": (-0.37150674222969826, 5.210160433742566),
    "129 00": (-0.37150674222969826, 5.210160433742566),
    "date 12": (0.37146147112045136, 7.310221262625138),
    "49": (0.37111726548338336, 4.745271905163602),
    "client apple": (-0.37095234959335865, 5.388408665148885),
    "hello": (0.3700583437304294, 2.975111547739008),
    "33 45": (-0.36890069563464106, 7.492542819419093),
    "commande bonjour": (-0.36796855996362127, 5.966486515924044),
    "equipe microsoft": (0.3679132793597695, 4.882473026677086),
    "vtore": (0.36655367123119903, 6.704085459054823),
    "39 ou": (-0.36574371770362274, 7.7156863707333025),
    "98": (-0.36572719675242493, 6.4629234022379345),
    "google verification": (-0.3645548072051341, 5.966486515924044),
    "expediteur chronopost": (-0.3642836098750403, 5.3643111135698245),
    "chronopost livraison": (-0.3642836098750403, 5.3643111135698245),
    "orange": (-0.3642566771036033, 3.8086759071287006),
    "22": (0.36379285536897576, 5.923926901505247),
    "simon": (-0.36338567815562367, 7.022539190173357),
    "pu etre": (0.3632070236598522, 3.803663365305156),
    "etre livre": (0.3632070236598522, 3.803663365305156),
    "ameli": (0.3626254366014901, 4.771247391566861),
    "le 12": (0.3624323573391392, 7.15607058279788),
    "netflix cher": (0.3617384527368131, 6.268767387796977),
    "suivi": (-0.361658916969855, 3.507269352251354),
    "utilisateur nous": (0.36130607810129184, 3.849707303806563),
    "cher utilisateur": (0.36130607810129184, 3.849707303806563),
    "utilisateur": (0.36130607810129184, 3.849707303806563),
    "de verifier": (-0.3590197783504645, 3.4286574646817005),
    "rapidement madame": (-0.3575050541862858, 7.492542819419093),
    "colis pas": (0.35582245984620336, 3.8086759071287006),
    "presence john": (0.35488389796017916, 7.15607058279788),
    "bonjour vous": (0.3540055553141633, 4.118374110144856),
    "stark": (0.3538844491211313, 5.3407806161596305),
    "47": (0.35316119024598464, 6.329392009613412),
    "dhl": (-0.35297907035656606, 4.365782283458698),
    "le 10": (0.35262643440156677, 7.492542819419093),
    "depuis berlin": (-0.35141751874101784, 5.843884193831711),
    "berlin le": (-0.35141751874101784, 5.843884193831711),
    "berlin": (-0.35141751874101784, 5.843884193831711),
    "99 hello": (-0.3511883526346469, 6.904756154516973),
    "bonjour sarah": (0.3511421064857317, 7.022539190173357),
    "sarah nous": (0.3511421064857317, 7.022539190173357),
    "33 30": (-0.35105635121668016, 7.310221262625138),
    "expediteur laposte": (0.3502510660128908, 5.636244829053466),
    "laposte livraison": (0.3502510660128908, 5.636244829053466),
    "cet": (-0.350135653030667, 3.5109937513423364),
    "requis": (0.34989242195164477, 3.604812506559991),
    "33 14": (-0.3496347351543221, 7.7156863707333025),
    "40 sont": (0.3489854897949818, 5.170155099128867),
    "de 49": (0.34895098204360314, 4.797915638649023),
    "reglement": (0.34796861780255445, 3.8655387690232437),
    "cet email": (-0.3467793328967001, 3.5147320734529437),
    "ordinateur microsoft": (-0.34648702552203453, 4.580192154804153),
    "de paiement": (-0.34616226809272765, 3.881624906774868),
    "bien": (-0.345339429777096, 2.7303688846213365),
    "url_token vous": (-0.3450153283126583, 3.5147320734529437),
    "client netflix": (0.3444536789217795, 5.438419085723546),
    "simon directeur": (-0.34348135210359604, 7.15607058279788),
    "merci sophie": (-0.34307863664702626, 7.022539190173357),
    "requise": (-0.3398605003465944, 3.2613390744797948),
    "agissez pas": (0.33961143183256465, 3.7887747528114057),
    "48h": (0.33961143183256465, 3.7887747528114057),
    "verrouille equipe": (0.33961143183256465, 3.7887747528114057),
    "equipe de": (0.33961143183256465, 3.7887747528114057),
    "verrouille": (0.33961143183256465, 3.7887747528114057),
    "agissez": (0.33961143183256465, 3.7887747528114057),
    "compte pour": (0.33961143183256465, 3.7887747528114057),
    "maintenant cliquez": (0.33961143183256465, 3.7887747528114057),
    "vous agissez": (0.33961143183256465, 3.7887747528114057),
    "securite vous": (0.33961143183256465, 3.7887747528114057),
    "sous 48h": (0.33961143183256465, 3.7887747528114057),
    "sera verrouille": (0.33961143183256465, 3.7887747528114057),
    "pas sous": (0.33961143183256465, 3.7887747528114057),
    "bonjour je": (0.3387070588683265, 4.580192154804153),
    "hello vous": (0.3383208842848635, 4.636072613198609),
    "hello dans": (0.33712614723586926, 5.4910628192089685),
    "amazon par": (-0.3366983856908809, 5.273339335364098),
    "securite amazon": (-0.3366983856908809, 5.273339335364098),
    "suite": (0.33668910659398527, 3.7548732011357244),
    "suite une": (0.33668910659398527, 3.7548732011357244),
    "le 09": (0.33660409866073415, 6.904756154516973),
    "commande madame": (0.33550099037434244, 6.904756154516973),
    "equipe apple": (-0.33420230760783465, 4.882473026677086),
    "de 50": (0.33355332880392136, 4.486860215011934),
    "bancaires": (0.332933867092191, 3.026634700764509),
    "une connexion": (0.33207710154311787, 3.798675823794117),
    "connexion inhabituelle": (0.33207710154311787, 3.798675823794117),
    "reste": (0.3318953011657592, 3.1723915884632983),
    "nouvelle": (-0.3313882632571271, 3.7083531855008314),
    "monsieur nous": (-0.3303839181670906, 4.5068608817186036),
    "point": (-0.32912656865617734, 5.076629041118044),
    "reinitialiser url_token": (0.32842868970601696, 3.7937130344519883),
    "est en": (-0.32840594327832223, 3.914594926012438),
    "lien": (-0.32787020901744995, 4.234446281397611),
    "question": (0.3267494278517607, 5.464394572126807),
    "question sur": (0.3267494278517607, 5.464394572126807),
    "securite spotify": (-0.3265665161689391, 5.605473170386713),
    "confidentiel hello": (-0.3263415649914656, 7.022539190173357),
    "inchange equipe": (-0.3258909292796397, 4.234446281397611),
    "inchange": (-0.3258909292796397, 4.234446281397611),
    "email votre": (-0.3258909292796397, 4.234446281397611),
    "securite ce": (-0.3258909292796397, 4.234446281397611),
    "cette demande": (-0.3258909292796397, 4.234446281397611),
    "ce lien": (-0.3258909292796397, 4.234446281397611),
    "etes pas": (-0.3258909292796397, 4.234446281397611),
    "pas origine": (-0.3258909292796397, 4.234446281397611),
    "60 minutes": (-0.3258909292796397, 4.234446281397611),
    "minutes": (-0.3258909292796397, 4.234446281397611),
    "minutes cliquez": (-0.3258909292796397, 4.234446281397611),
    "de cette": (-0.3258909292796397, 4.234446281397611),
    "le mot": (-0.3258909292796397, 4.234446281397611),
    "dans 60": (-0.3258909292796397, 4.234446281397611),
    "origine": (-0.3258909292796397, 4.234446281397611),
    "origine de": (-0.3258909292796397, 4.234446281397611),
    "54": (0.3258798825939531, 6.537031374391656),
    "fedex nous": (0.32586966495872616, 7.310221262625138),
    "equipe fedex": (0.32586966495872616, 7.310221262625138),
    "recu spotify": (0.3256669125631335, 7.15607058279788),
    "spotify commande": (0.3256669125631335, 7.15607058279788),
    "monsieur profitez": (0.32534044539184837, 5.806143865848864),
    "vous devez": (0.32532899657063, 3.798675823794117),
    "devez": (0.32532899657063, 3.798675823794117),
    "33 27": (-0.3251135239940193, 7.492542819419093),
    "reinitialisation": (0.32427353441797796, 4.219178809266822),
    "reinitialisation de": (0.32427353441797796, 4.219178809266822),
    "voter": (-0.32358374044302773, 5.769776221677989),
    "pour recevoir": (0.32264516146662664, 3.1281711199839317),
    "recevoir": (0.32264516146662664, 3.1281711199839317),
    "reinitialiser votre": (-0.32178100839837587, 4.242168327491521),
    "avons temporairement": (0.3216810782035915, 3.828981173289446),
    "inhabituelle votre": (0.3210739861009806, 3.803663365305156),
    "99": (-0.32079852369281747, 2.9971874994382075),
    "expire dans": (-0.3199031718770735, 4.2499504679335764),
    "lien expire": (-0.3199031718770735, 4.2499504679335764),
    "attente des": (-0.3198552005992962, 4.242168327491521),
    "06 2026": (-0.319362361964576, 5.769776221677989),
    "06": (-0.319362361964576, 5.769776221677989),
    "passe restera": (-0.317882661394322, 4.2499504679335764),
    "restera inchange": (-0.317882661394322, 4.2499504679335764),
    "restera": (-0.317882661394322, 4.2499504679335764),
    "connexion bonjour": (-0.3178739150285819, 6.010938278494877),
    "votre remboursement": (0.3175473836642899, 5.3643111135698245),
    "disponible felicitations": (0.3175473836642899, 5.3643111135698245),
    "de 128": (0.3175473836642899, 5.3643111135698245),
    "remboursement de": (0.3175473836642899, 5.3643111135698245),
    "128": (0.3175473836642899, 5.3643111135698245),
    "128 50": (0.3175473836642899, 5.3643111135698245),
    "remboursement": (0.3175473836642899, 5.3643111135698245),
    "50 est": (0.3175473836642899, 5.3643111135698245),
    "mise": (0.3173458949327779, 3.778970752714785),
    "passe url_token": (-0.3172007150282485, 4.242168327491521),
    "reinitialiser le": (-0.3168804567715611, 4.2499504679335764),
    "vandelay": (0.3167461846417972, 5.388408665148885),
    "securite": (-0.3164979133683576, 2.4752629826041685),
    "48h votre": (0.31638609181025285, 3.803663365305156),
    "avant": (0.3162234673042858, 3.133273171867827),
    "confiance netflix": (-0.31543170325227526, 5.769776221677989),
    "33 78": (-0.315233097240233, 7.492542819419093),
    "alerte de": (-0.3144144949574039, 3.4852096341866217),
    "jour de": (0.3141506118397576, 3.7838607380089764),
    "mise jour": (0.3141506118397576, 3.7838607380089764),
    "compte bonjour": (-0.3136897696508373, 5.636244829053466),
    "89 90": (0.3135962927274533, 5.295318242082873),
    "de 89": (0.3135962927274533, 5.295318242082873),
    "avez demande": (-0.31339209588570277, 4.2499504679335764),
    "sera retourne": (0.31264592446812167, 3.803663365305156),
    "raison": (0.31264592446812167, 3.803663365305156),
    "sous 72h": (0.31264592446812167, 3.803663365305156),
    "72h": (0.31264592446812167, 3.803663365305156),
    "livre en": (0.31264592446812167, 3.803663365305156),
    "incomplete": (0.31264592446812167, 3.803663365305156),
    "72h votre": (0.31264592446812167, 3.803663365305156),
    "url_token sans": (0.31264592446812167, 3.803663365305156),
    "expediteur": (0.31264592446812167, 3.803663365305156),
    "retourne expediteur": (0.31264592446812167, 3.803663365305156),
    "retourne": (0.31264592446812167, 3.803663365305156),
    "en raison": (0.31264592446812167, 3.803663365305156),
    "incomplete des": (0.31264592446812167, 3.803663365305156),
    "raison une": (0.31264592446812167, 3.803663365305156),
    "maintenant bonjour": (-0.3121892504120985, 6.329392009613412),
    "de votre": (-0.3118363418389927, 2.8215848928929983),
    "suivre": (-0.3113915214086503, 4.2499504679335764),
    "90 ou": (-0.3107037369089594, 7.310221262625138),
    "facturation paypal": (0.3101640307544627, 5.464394572126807),
    "rib": (0.31015601798902204, 3.778970752714785),
    "salaire": (0.31015601798902204, 3.778970752714785),
    "depuis votre": (-0.30986610081121185, 4.2499504679335764),
    "daily": (0.30960680135837276, 5.546632670363779),
    "sujet daily": (0.30960680135837276, 5.546632670363779),
    "daily date": (0.30960680135837276, 5.546632670363779),
    "tout": (-0.30950484773549586, 3.4707689500318275),
    "hello je": (-0.3086991947574912, 5.3643111135698245),
    "devez verifier": (0.308268074125215, 3.8086759071287006),
    "presence daniel": (0.30820851891412976, 6.799395638859147),
    "frais ici": (0.30795759617271806, 3.8086759071287006),
    "reglez les": (-0.3071612061088787, 4.2499504679335764),
    "et reglez": (-0.3071612061088787, 4.2499504679335764),
    "colis tout": (-0.30702290818478134, 4.2499504679335764),
    "depuis": (-0.3067911739524502, 3.4459889210333405),
    "suivre votre": (-0.3067763912325186, 4.257793645394601),
    "colis suivi": (-0.3067078339144523, 4.257793645394601),
    "passe maintenant": (0.3064486543344833, 3.798675823794117),
    "35": (0.3062437715578879, 6.537031374391656),
    "frais url_token": (-0.3058061522309636, 4.2499504679335764),
    "doivent etre": (-0.3057997249220589, 4.257793645394601),
    "doivent": (-0.3057997249220589, 4.257793645394601),
    "finaliser la": (-0.30537626677171587, 4.2499504679335764),
    "37": (0.3053611219709777, 6.537031374391656),
    "et payez": (0.30531959982037404, 3.8086759071287006),
    "payez": (0.30531959982037404, 3.8086759071287006),
    "payez les": (0.30531959982037404, 3.8086759071287006),
    "sujet retrospective": (-0.30509014387583977, 5.4910628192089685),
    "retrospective": (-0.30509014387583977, 5.4910628192089685),
    "retrospective date": (-0.30509014387583977, 5.4910628192089685),
    "colis sera": (0.30489083123261945, 3.8086759071287006),
    "96 ou": (-0.30456395722179336, 7.492542819419093),
    "demande reinitialiser": (-0.3043118684914968, 4.265698824901715),
    "moreau": (-0.3038936031528712, 6.704085459054823),
    "securite microsoft": (0.30388418915390164, 5.734684901866719),
    "du mois": (0.30384772676163124, 3.8187770031152044),
    "action requise": (-0.30383028392639017, 4.548103840252653),
    "vous pouvez": (-0.30364305775405304, 4.2499504679335764),
    "pouvez": (-0.30364305775405304, 4.2499504679335764),
    "passe de": (-0.3033963304116097, 4.257793645394601),
    "38": (-0.3032341999639013, 7.15607058279788),
    "ignorez": (-0.3028781096118122, 4.2499504679335764),
    "demande ignorez": (-0.3028781096118122, 4.2499504679335764),
    "ignorez cet": (-0.3028781096118122, 4.2499504679335764),
    "10h00": (0.3025839546870109, 7.022539190173357),
    "2026 10h00": (0.3025839546870109, 7.022539190173357),
    "10h00 lieu": (0.3025839546870109, 7.022539190173357),
    "colis madame": (0.30223426553331806, 6.6170740820651925),
    "securite linkedin": (0.3016550970426291, 5.438419085723546),
    "url_token orange": (-0.30162498370446683, 5.438419085723546),
    "sans": (0.3009070719211484, 3.0833875173569583),
    "martin": (-0.300751189423982, 6.704085459054823),
}
# --- End of fixed values. ---


@dataclass(frozen=True)
class LinearScorer:
    """Thirty scaled tabular weights plus a bounded table of term weights (at most 400)."""

    tab: dict[str, tuple[float, float, float]] = field(default_factory=lambda: dict(TAB_WEIGHTS))
    terms: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(TERM_WEIGHTS))
    intercept: float = INTERCEPT
    phish_threshold: float = PHISH_THRESHOLD
    suspect_threshold: float = SUSPECT_THRESHOLD

    def with_scaler(self, scaler: dict[str, tuple[float, float]]) -> "LinearScorer":
        """Same coefficients on another population's mean and scale."""
        return replace(self, tab={f: (c, *scaler[f]) for f, (c, _, _) in self.tab.items()})

    def tab_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, f, *self.tab[f]) for i, f in enumerate(FEATURES)]
        return spark.createDataFrame(
            rows, "feature_idx int, feature string, coef double, mean double, scale double"
        )

    def term_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(t, w, idf) for t, (w, idf) in self.terms.items()]
        return spark.createDataFrame(rows, "term string, w double, idf double")


_TERM = T.StructType([T.StructField("w", T.DoubleType()), T.StructField("idf", T.DoubleType())])
_EXPORT = T.StructType(
    [
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("tab_coef", T.ArrayType(T.DoubleType())),
        T.StructField("scaler_mean", T.ArrayType(T.DoubleType())),
        T.StructField("scaler_scale", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("terms", T.MapType(T.StringType(), _TERM)),
        T.StructField("suspect_threshold", T.DoubleType()),
        T.StructField("phish_threshold", T.DoubleType()),
    ]
)


def read_scorer(spark: SparkSession, path: str) -> LinearScorer:
    """Load an exported scorer: one JSON object, a few hundred numbers."""
    row = spark.read.schema(_EXPORT).option("multiLine", True).json(path).first()
    cols = zip(row["feature_names"], row["tab_coef"], row["scaler_mean"], row["scaler_scale"])
    return LinearScorer(
        tab={f: (c, m, s) for f, c, m, s in cols},
        terms={t: (v["w"], v["idf"]) for t, v in row["terms"].items()},
        intercept=row["intercept"],
        phish_threshold=row["phish_threshold"],
        suspect_threshold=row["suspect_threshold"],
    )


def write_scorer(spark: SparkSession, scorer: LinearScorer, path: str, top: int = 400) -> None:
    """Export contract: tabular block and the ``top`` heaviest terms as one JSON object."""
    heaviest = sorted(scorer.terms.items(), key=lambda kv: (-abs(kv[1][0]), kv[0]))[:top]
    tab = [scorer.tab[f] for f in FEATURES]
    row = (
        FEATURES, [t[0] for t in tab], [t[1] for t in tab], [t[2] for t in tab], scorer.intercept,
        {t: {"w": w, "idf": idf} for t, (w, idf) in heaviest},
        scorer.suspect_threshold, scorer.phish_threshold,
    )
    spark.createDataFrame([row], _EXPORT).coalesce(1).write.mode("errorifexists").json(path)


def top_weights(weights: DataFrame, n: int = 400) -> DataFrame:
    """The ``n`` heaviest terms by absolute weight; a top-k, not a full sort."""
    return weights.orderBy(F.abs("w").desc(), "term").limit(n)
